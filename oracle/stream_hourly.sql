-- Hours the watermark (one hour behind the latest event) has closed.
with hours as (
  select date_trunc('hour', created_at) activity_hour, event_type, count(*) event_count,
         count(distinct actor_id) unique_actors, count(distinct repo_id) unique_repos
  from ev group by all
)
select *,
  round((event_count / nullif(unique_actors, 0))::decimal(18,10), 2)::double events_per_actor,
  round((unique_repos / nullif(unique_actors, 0))::decimal(18,10), 2)::double repos_per_actor
from hours
where activity_hour + interval 1 hour <= (select max(created_at) - interval 1 hour from ev)
