with daily as (
  select repo_id, repo_name, date '2024-01-31' - created_at::date age, count(*) n
  from ev where event_type = 'WatchEvent' and created_at >= timestamp '2024-01-16 00:00:00'
  group by all
), before_rows as (
  select repo_id, round(avg(n)::decimal(18,10), 2)::double usual, sum(n)::bigint total
  from daily where age between 2 and 8 group by repo_id
), compared as (
  select d.repo_id, d.repo_name, d.n, b.usual, b.total, d.n / nullif(b.usual, 0) speed
  from daily d left join before_rows b using (repo_id) where d.age = 1 and d.n >= 5
)
select repo_id, repo_name, split_part(repo_name, '/', 1) "owner", n stars_recent,
  coalesce(usual, 0) avg_daily_stars_7d, coalesce(total, 0) total_stars_7d,
  round(speed::decimal(18,10), 2)::double velocity_ratio,
  round((n - coalesce(usual, 0))::decimal(18,10), 0)::double stars_above_baseline,
  case when speed >= 10 then 'explosive' when speed >= 5 then 'viral'
       when speed >= 3 then 'accelerating' else 'steady' end velocity_class,
  usual is null no_prior_baseline
from compared
