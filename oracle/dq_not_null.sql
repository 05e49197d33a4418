select 'events' table_name, name column_name, failures
from (select count(*) - count(event_id) event_id, count(*) - count(event_type) event_type,
             count(*) - count(repo_name) repo_name,
             count(*) - count(repo_id) repo_id, count(*) - count(actor_login) actor_login,
             count(*) - count(org_login) org_login from ev)
unpivot (failures for name in (event_id, event_type, repo_name, repo_id, actor_login, org_login))
