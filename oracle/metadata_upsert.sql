with versions as (
  select *, 0 fetched from meta
  union all by name
  select m.* replace ((m.stargazers_count + e.stars)::bigint as stargazers_count, e.last_at as fetched_at),
         1 fetched
  from meta m join (select repo_id, count_if(event_type = 'WatchEvent') stars, max(created_at) last_at
                    from ev group by repo_id) e using (repo_id)
)
select * exclude (fetched, topics), array_to_string(topics, ',') topics from versions
qualify row_number() over (partition by repo_id order by fetched_at desc, fetched desc) = 1
