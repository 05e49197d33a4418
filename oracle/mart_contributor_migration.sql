with movers as (
  select actor_id, actor_login, count(distinct org_login) org_count,
    array_to_string(list_sort(list(distinct org_login) filter (org_login is not null)), ',') orgs,
    count(*) total_cross_org_events
  from ev
  where org_id is not null and event_type in ('PushEvent', 'PullRequestEvent', 'IssuesEvent')
    and not contains(actor_login, '[bot]') and created_at >= timestamp '2023-11-02 00:00:00'
  group by actor_id, actor_login
)
select m.*, p.repos_contributed_to, p.contributor_type, p.active_days
from movers m left join int_contributor_profiles p using (actor_id)
where org_count > 1
