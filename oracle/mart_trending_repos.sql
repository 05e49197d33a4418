select *, rank() over (partition by activity_date order by activity_score desc) daily_rank,
  if(stars = 0, 0.0::double, round((forks / stars)::decimal(18,10), 3)::double) fork_to_star_ratio,
  if(stars = 0, 0.0::double, round((pull_requests / stars)::decimal(18,10), 3)::double)
    pr_to_star_ratio,
  unique_pushers > 1 has_community_contributors
from int_repo_daily_activity
where activity_score > 0 and activity_date >= date '2024-01-01'
  and "owner" <> 'github' and "owner" <> 'dependabot' and not contains(repo_name, '/.github')
