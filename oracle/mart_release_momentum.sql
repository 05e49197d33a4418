with recent as (select * from ev where created_at >= timestamp '2023-11-02 00:00:00'),
per_repo as (
  select repo_id, count_if(event_type = 'PullRequestEvent') pr_count,
    count(distinct actor_id) filter (event_type = 'PullRequestEvent') unique_pr_authors,
    count_if(event_type = 'PushEvent') push_count,
    count(distinct actor_id) filter (event_type = 'PushEvent') unique_pushers,
    count_if(event_type = 'WatchEvent') star_count
  from recent group by repo_id
), released as (
  select repo_id, repo_name, count(*) release_count, min(created_at) first_release_at,
    max(created_at) latest_release_at, count(distinct actor_id) unique_releasers
  from recent where event_type = 'ReleaseEvent' group by all
)
select repo_id, repo_name, split_part(repo_name, '/', 1) "owner", release_count, first_release_at,
  latest_release_at, unique_releasers,
  date_diff('day', first_release_at, latest_release_at) release_span_days,
  pr_count::bigint pr_count, unique_pr_authors, push_count::bigint push_count, unique_pushers,
  star_count::bigint star_count,
  round((release_count / 3)::decimal(18,10), 2)::double releases_per_30_days,
  round((pr_count / release_count)::decimal(18,10), 2)::double prs_per_release,
  case when release_count >= 5 and unique_pr_authors >= 3 then 'active_oss'
       when release_count >= 3 and pr_count > 0 then 'growing' else 'early_release' end project_stage
from released join per_repo using (repo_id)
where push_count > 0
