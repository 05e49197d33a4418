with e as (select *, cast(created_at as date) as day from ev),
days as (select distinct repo_id, repo_name, day from e),
joined as (
  select k.*, coalesce(w.n, 0) stars, coalesce(p.n, 0) pushes, coalesce(p.who, 0) unique_pushers,
         coalesce(f.n, 0) forks, coalesce(q.n, 0) pull_requests, coalesce(i.n, 0) issues
  from days k
  left join (select repo_id r, day as d, repo_name, count(*) n from e
             where event_type = 'WatchEvent' group by all) w on w.r = k.repo_id and w.d = k.day
  left join (select repo_id r, day as d, repo_name, count(*) n, count(distinct actor_id) who from e
             where event_type = 'PushEvent' group by all) p on p.r = k.repo_id and p.d = k.day
  left join (select repo_id r, day as d, repo_name, count(*) n from e
             where event_type = 'ForkEvent' group by all) f on f.r = k.repo_id and f.d = k.day
  left join (select repo_id r, day as d, repo_name, count(*) n from e
             where event_type = 'PullRequestEvent' group by all) q on q.r = k.repo_id and q.d = k.day
  left join (select repo_id r, day as d, repo_name, count(*) n from e
             where event_type = 'IssuesEvent' group by all) i on i.r = k.repo_id and i.d = k.day
)
select * exclude (day), day activity_date, split_part(repo_name, '/', 1) "owner",
       cast(stars + 2 * forks + 3 * pull_requests + 2.5 * unique_pushers + 1.5 * issues as double)
         activity_score
from joined
