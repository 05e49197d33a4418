with people as (
  select *, event_type in ('PushEvent', 'PullRequestEvent') built from ev
  where created_at >= timestamp '2023-11-02 00:00:00'
    and not contains(actor_login, '[bot]') and not suffix(actor_login, '-bot')
), counted as (
  select actor_id, actor_login, count(distinct repo_id) repos_contributed_to,
    count(distinct repo_id) filter (event_type = 'PushEvent') repos_pushed_to,
    count(distinct repo_id) filter (event_type = 'PullRequestEvent') repos_pr_to,
    count(distinct repo_id) filter (event_type = 'IssuesEvent') repos_issues_on,
    count(distinct repo_id) filter (event_type = 'WatchEvent') repos_starred,
    count(*) total_events, count(distinct cast(created_at as date)) active_days,
    min(created_at) first_seen, max(created_at) last_seen,
    count(distinct repo_id) filter (built) built_repos
  from people group by actor_id, actor_login
)
select * exclude (built_repos),
  case when built_repos >= 5 then 'polyglot_contributor'
       when repos_pushed_to = 0 and repos_starred >= 10 then 'scout'
       when built_repos >= 2 then 'active_contributor' else 'casual' end contributor_type
from counted
