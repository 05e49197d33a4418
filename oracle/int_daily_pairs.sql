select cast(created_at as date) as activity_date, event_type, actor_id, actor_login, repo_id, repo_name, org_id, org_login,
    count(*) as n, min(created_at) as first_at, max(created_at) as last_at
from ev group by all
