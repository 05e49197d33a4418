-- The binding of the supplied events to the event table, in DuckDB.
with parsed as (
  select event_id, ts, user_id u, event_type kind,
         cast(json_extract(props, '$.k') as bigint) k, cast(round(value * 100) as bigint) % 10 c,
         cast(floor(user_id / 3.0) as bigint) team
  from events
), placed as (
  select *, case
      when ts >= timestamp '2024-01-30 00:00:00' and k >= 70 then 41
      when ts >= timestamp '2024-01-26 00:00:00' and k between 60 and 69 then 40
      when k = 98 then 41
      when c in (5, 6) then case when k <> 97 then 50 + team * 10 + k % 10 end
      when u % 10 = 2 then least(cast(floor(k * k / 245.0) as bigint), 39) % 3
      else least(cast(floor(k * k / 245.0) as bigint), 39) end r
  from parsed
), owned as (
  select *,
    case when r >= 50 then case when team % 2 = 0 then 100 + cast(floor(u / 12.0) as bigint) end
         when r % 4 = 3 then null when r = 38 then 99 else r % 6 end o,
    ts - to_days(cast(case when r < 20 and c between 7 and 9 then 30 * (c - 6) else 0 end as integer)) happened
  from placed
)
select event_id,
  case when u % 10 = 0 then 'WatchEvent' when u % 10 = 1 then 'IssuesEvent'
       when kind = 'view' then 'WatchEvent' when kind = 'click' then 'PushEvent'
       when kind = 'purchase' then 'PullRequestEvent'
       when kind = 'signup' then if(event_id % 2 = 0, 'ForkEvent', 'IssuesEvent')
       else ['ReleaseEvent', 'CreateEvent', 'WatchEvent', 'IssueCommentEvent'][event_id % 4 + 1]
  end event_type,
  u actor_id,
  case when c = 6 and k = 4 then null
       when u % 29 = 0 then format('app-{}[bot]', u) when u % 31 = 0 then format('svc-{}-bot', u)
       when u % 13 = 0 and event_id % 2 = 0 then format('user-{}-renamed', u)
       else format('user-{}', u) end actor_login,
  cast(r as bigint) repo_id,
  case when r is null then format('ghost/repo-{}', u)
       when r = 3 then 'github/repo-3' when r = 5 then 'org-5/.github'
       when r = 7 and u % 2 = 0 then 'dev-7/repo-7-old'
       else coalesce('org-' || o, 'dev-' || r) || '/repo-' || r || if(r >= 50 and k = 49, '-old', '')
  end repo_name,
  cast(o as bigint) org_id,
  case when c = 5 and k = 3 then null else 'org-' || o end org_login,
  happened created_at,
  strftime(ts, '%Y-%m-%d-%-H') source_file
from owned
