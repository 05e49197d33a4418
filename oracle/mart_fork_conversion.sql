with recent as (select * from ev where created_at >= timestamp '2023-11-02 00:00:00'),
forked as (
  select repo_id, repo_name, count(*) fork_count, count(distinct actor_id) unique_forkers
  from recent where event_type = 'ForkEvent' group by all having count(*) > 1
), counted as (
  select forked.*, coalesce(pr.n, 0) pr_count, coalesce(pr.who, 0) unique_pr_authors,
         coalesce(st.n, 0) star_count, coalesce(pr.n, 0) / fork_count conversion
  from forked
  left join (select repo_id, count(*) n, count(distinct actor_id) who from recent
             where event_type = 'PullRequestEvent' group by repo_id) pr using (repo_id)
  left join (select repo_id, count(*) n from ev
             where event_type = 'WatchEvent' group by repo_id) st using (repo_id)
)
select * exclude (conversion), split_part(repo_name, '/', 1) "owner",
  round(conversion::decimal(18,10), 3)::double fork_to_pr_conversion,
  case when pr_count = 0 then if(fork_count >= 3, 'fork_graveyard', 'early_stage')
       else if(conversion >= 0.5, 'thriving', 'growing') end community_health
from counted
