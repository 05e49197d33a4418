with born as (
  select repo_id, repo_name, split_part(repo_name, '/', 1) "owner",
    min(created_at)::date first_seen_date, date '2024-01-31' - min(created_at)::date age_days
  from ev where event_type = 'CreateEvent' group by repo_id, repo_name
), lifetime as (
  select repo_id, sum(stars)::bigint total_stars, sum(pushes)::bigint total_pushes,
    sum(forks)::bigint total_forks, sum(pull_requests)::bigint total_prs,
    sum(issues)::bigint total_issues, sum(activity_score) total_activity_score,
    max(activity_score) peak_daily_score, count(*) active_days
  from int_repo_daily_activity group by repo_id
)
select *,
  round((total_stars / nullif(age_days, 0))::decimal(18,10), 2)::double stars_per_day,
  round((total_activity_score / nullif(age_days, 0))::decimal(18,10), 2)::double activity_per_day,
  case when age_days <= 7 and total_stars >= 500 then 'instant_hit'
       when age_days <= 14 and total_stars >= 200 then 'fast_mover'
       when age_days <= 30 and total_stars >= 50 then 'rising' else 'early_stage' end breakout_tier
from born join lifetime using (repo_id)
where age_days <= 30 and total_activity_score > 0 and "owner" not in ('github', 'dependabot')
