select repo_id, arg_max(repo_name, (created_at, repo_name)) repo_name, count(*) recent_events
from ev
where repo_id is not null and created_at >= timestamp '2024-01-24 00:00:00'
  and not exists (select 1 from meta m where m.repo_id = ev.repo_id
                  and m.fetched_at >= timestamp '2024-01-24 00:00:00')
group by repo_id order by recent_events desc, repo_id limit 500
