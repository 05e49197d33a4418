select * from int_repo_daily_activity
