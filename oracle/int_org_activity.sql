select org_id, org_login,
  count(distinct repo_id) repos_active, count(distinct actor_id) unique_contributors,
  count(distinct actor_id) filter (event_type = 'PushEvent') unique_pushers,
  count(distinct actor_id) filter (event_type = 'PullRequestEvent') unique_pr_authors,
  count(*) total_events,
  count(*) filter (event_type = 'PushEvent') push_events,
  count(*) filter (event_type = 'PullRequestEvent') pr_events,
  count(*) filter (event_type = 'ReleaseEvent') release_events,
  count(*) filter (event_type = 'WatchEvent') star_events,
  min(created_at) first_activity, max(created_at) last_activity
from ev
where created_at >= timestamp '2024-01-01 00:00:00'
group by all having org_id is not null and org_login is not null
