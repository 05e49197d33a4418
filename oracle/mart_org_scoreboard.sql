select *,
  round((push_events / total_events)::decimal(18,10), 3)::double push_ratio,
  round((pr_events / total_events)::decimal(18,10), 3)::double pr_ratio,
  round((unique_contributors / repos_active)::decimal(18,10), 2)::double contributors_per_repo,
  case when unique_contributors < 3 then 'indie' when unique_contributors < 10 then 'startup'
       when unique_contributors < 50 then 'mid_size' else 'enterprise' end org_tier,
  rank() over (order by total_events desc) activity_rank
from int_org_activity where repos_active > 1
