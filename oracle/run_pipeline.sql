select 'stg_watch_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_watch_events)
union all select 'stg_push_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_push_events)
union all select 'stg_fork_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_fork_events)
union all select 'stg_pull_request_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_pull_request_events)
union all select 'stg_issue_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_issue_events)
union all select 'stg_release_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_release_events)
union all select 'stg_create_events' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'created_at', 'nulls': count(*) filter (created_at is null), 'millionths': null},
    {'column_name': 'event_id', 'nulls': count(*) filter (event_id is null), 'millionths': cast(sum(cast(round(cast(event_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'source_file', 'nulls': count(*) filter (source_file is null), 'millionths': null}
] as columns from stg_create_events)
union all select 'int_repo_daily_activity' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'activity_date', 'nulls': count(*) filter (activity_date is null), 'millionths': null},
    {'column_name': 'activity_score', 'nulls': count(*) filter (activity_score is null), 'millionths': cast(sum(cast(round(cast(activity_score as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'forks', 'nulls': count(*) filter (forks is null), 'millionths': cast(sum(cast(round(cast(forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'issues', 'nulls': count(*) filter (issues is null), 'millionths': cast(sum(cast(round(cast(issues as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'pull_requests', 'nulls': count(*) filter (pull_requests is null), 'millionths': cast(sum(cast(round(cast(pull_requests as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pushes', 'nulls': count(*) filter (pushes is null), 'millionths': cast(sum(cast(round(cast(pushes as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'stars', 'nulls': count(*) filter (stars is null), 'millionths': cast(sum(cast(round(cast(stars as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from int_repo_daily_activity)
union all select 'int_contributor_profiles' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'active_days', 'nulls': count(*) filter (active_days is null), 'millionths': cast(sum(cast(round(cast(active_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'contributor_type', 'nulls': count(*) filter (contributor_type is null), 'millionths': null},
    {'column_name': 'first_seen', 'nulls': count(*) filter (first_seen is null), 'millionths': null},
    {'column_name': 'last_seen', 'nulls': count(*) filter (last_seen is null), 'millionths': null},
    {'column_name': 'repos_contributed_to', 'nulls': count(*) filter (repos_contributed_to is null), 'millionths': cast(sum(cast(round(cast(repos_contributed_to as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_issues_on', 'nulls': count(*) filter (repos_issues_on is null), 'millionths': cast(sum(cast(round(cast(repos_issues_on as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_pr_to', 'nulls': count(*) filter (repos_pr_to is null), 'millionths': cast(sum(cast(round(cast(repos_pr_to as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_pushed_to', 'nulls': count(*) filter (repos_pushed_to is null), 'millionths': cast(sum(cast(round(cast(repos_pushed_to as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_starred', 'nulls': count(*) filter (repos_starred is null), 'millionths': cast(sum(cast(round(cast(repos_starred as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_events', 'nulls': count(*) filter (total_events is null), 'millionths': cast(sum(cast(round(cast(total_events as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from int_contributor_profiles)
union all select 'int_org_activity' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'first_activity', 'nulls': count(*) filter (first_activity is null), 'millionths': null},
    {'column_name': 'last_activity', 'nulls': count(*) filter (last_activity is null), 'millionths': null},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'pr_events', 'nulls': count(*) filter (pr_events is null), 'millionths': cast(sum(cast(round(cast(pr_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'push_events', 'nulls': count(*) filter (push_events is null), 'millionths': cast(sum(cast(round(cast(push_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'release_events', 'nulls': count(*) filter (release_events is null), 'millionths': cast(sum(cast(round(cast(release_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_active', 'nulls': count(*) filter (repos_active is null), 'millionths': cast(sum(cast(round(cast(repos_active as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'star_events', 'nulls': count(*) filter (star_events is null), 'millionths': cast(sum(cast(round(cast(star_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_events', 'nulls': count(*) filter (total_events is null), 'millionths': cast(sum(cast(round(cast(total_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_contributors', 'nulls': count(*) filter (unique_contributors is null), 'millionths': cast(sum(cast(round(cast(unique_contributors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pr_authors', 'nulls': count(*) filter (unique_pr_authors is null), 'millionths': cast(sum(cast(round(cast(unique_pr_authors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from int_org_activity)
union all select 'mart_org_scoreboard' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'activity_rank', 'nulls': count(*) filter (activity_rank is null), 'millionths': cast(sum(cast(round(cast(activity_rank as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'contributors_per_repo', 'nulls': count(*) filter (contributors_per_repo is null), 'millionths': cast(sum(cast(round(cast(contributors_per_repo as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'first_activity', 'nulls': count(*) filter (first_activity is null), 'millionths': null},
    {'column_name': 'last_activity', 'nulls': count(*) filter (last_activity is null), 'millionths': null},
    {'column_name': 'org_id', 'nulls': count(*) filter (org_id is null), 'millionths': cast(sum(cast(round(cast(org_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'org_login', 'nulls': count(*) filter (org_login is null), 'millionths': null},
    {'column_name': 'org_tier', 'nulls': count(*) filter (org_tier is null), 'millionths': null},
    {'column_name': 'pr_events', 'nulls': count(*) filter (pr_events is null), 'millionths': cast(sum(cast(round(cast(pr_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pr_ratio', 'nulls': count(*) filter (pr_ratio is null), 'millionths': cast(sum(cast(round(cast(pr_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'push_events', 'nulls': count(*) filter (push_events is null), 'millionths': cast(sum(cast(round(cast(push_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'push_ratio', 'nulls': count(*) filter (push_ratio is null), 'millionths': cast(sum(cast(round(cast(push_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'release_events', 'nulls': count(*) filter (release_events is null), 'millionths': cast(sum(cast(round(cast(release_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_active', 'nulls': count(*) filter (repos_active is null), 'millionths': cast(sum(cast(round(cast(repos_active as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'star_events', 'nulls': count(*) filter (star_events is null), 'millionths': cast(sum(cast(round(cast(star_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_events', 'nulls': count(*) filter (total_events is null), 'millionths': cast(sum(cast(round(cast(total_events as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_contributors', 'nulls': count(*) filter (unique_contributors is null), 'millionths': cast(sum(cast(round(cast(unique_contributors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pr_authors', 'nulls': count(*) filter (unique_pr_authors is null), 'millionths': cast(sum(cast(round(cast(unique_pr_authors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_org_scoreboard)
union all select 'mart_release_momentum' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'first_release_at', 'nulls': count(*) filter (first_release_at is null), 'millionths': null},
    {'column_name': 'latest_release_at', 'nulls': count(*) filter (latest_release_at is null), 'millionths': null},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'pr_count', 'nulls': count(*) filter (pr_count is null), 'millionths': cast(sum(cast(round(cast(pr_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'project_stage', 'nulls': count(*) filter (project_stage is null), 'millionths': null},
    {'column_name': 'prs_per_release', 'nulls': count(*) filter (prs_per_release is null), 'millionths': cast(sum(cast(round(cast(prs_per_release as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'push_count', 'nulls': count(*) filter (push_count is null), 'millionths': cast(sum(cast(round(cast(push_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'release_count', 'nulls': count(*) filter (release_count is null), 'millionths': cast(sum(cast(round(cast(release_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'release_span_days', 'nulls': count(*) filter (release_span_days is null), 'millionths': cast(sum(cast(round(cast(release_span_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'releases_per_30_days', 'nulls': count(*) filter (releases_per_30_days is null), 'millionths': cast(sum(cast(round(cast(releases_per_30_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'star_count', 'nulls': count(*) filter (star_count is null), 'millionths': cast(sum(cast(round(cast(star_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pr_authors', 'nulls': count(*) filter (unique_pr_authors is null), 'millionths': cast(sum(cast(round(cast(unique_pr_authors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_releasers', 'nulls': count(*) filter (unique_releasers is null), 'millionths': cast(sum(cast(round(cast(unique_releasers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_release_momentum)
union all select 'mart_ecosystem_hourly' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'activity_hour', 'nulls': count(*) filter (activity_hour is null), 'millionths': null},
    {'column_name': 'event_count', 'nulls': count(*) filter (event_count is null), 'millionths': cast(sum(cast(round(cast(event_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'event_type', 'nulls': count(*) filter (event_type is null), 'millionths': null},
    {'column_name': 'events_per_actor', 'nulls': count(*) filter (events_per_actor is null), 'millionths': cast(sum(cast(round(cast(events_per_actor as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repos_per_actor', 'nulls': count(*) filter (repos_per_actor is null), 'millionths': cast(sum(cast(round(cast(repos_per_actor as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_actors', 'nulls': count(*) filter (unique_actors is null), 'millionths': cast(sum(cast(round(cast(unique_actors as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_repos', 'nulls': count(*) filter (unique_repos is null), 'millionths': cast(sum(cast(round(cast(unique_repos as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_ecosystem_hourly)
union all select 'mart_viral_velocity' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'avg_daily_stars_7d', 'nulls': count(*) filter (avg_daily_stars_7d is null), 'millionths': cast(sum(cast(round(cast(avg_daily_stars_7d as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'no_prior_baseline', 'nulls': count(*) filter (no_prior_baseline is null), 'millionths': null},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'stars_above_baseline', 'nulls': count(*) filter (stars_above_baseline is null), 'millionths': cast(sum(cast(round(cast(stars_above_baseline as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'stars_recent', 'nulls': count(*) filter (stars_recent is null), 'millionths': cast(sum(cast(round(cast(stars_recent as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_stars_7d', 'nulls': count(*) filter (total_stars_7d is null), 'millionths': cast(sum(cast(round(cast(total_stars_7d as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'velocity_class', 'nulls': count(*) filter (velocity_class is null), 'millionths': null},
    {'column_name': 'velocity_ratio', 'nulls': count(*) filter (velocity_ratio is null), 'millionths': cast(sum(cast(round(cast(velocity_ratio as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_viral_velocity)
union all select 'mart_trending_repos' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'activity_date', 'nulls': count(*) filter (activity_date is null), 'millionths': null},
    {'column_name': 'activity_score', 'nulls': count(*) filter (activity_score is null), 'millionths': cast(sum(cast(round(cast(activity_score as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'daily_rank', 'nulls': count(*) filter (daily_rank is null), 'millionths': cast(sum(cast(round(cast(daily_rank as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'fork_to_star_ratio', 'nulls': count(*) filter (fork_to_star_ratio is null), 'millionths': cast(sum(cast(round(cast(fork_to_star_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'forks', 'nulls': count(*) filter (forks is null), 'millionths': cast(sum(cast(round(cast(forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'has_community_contributors', 'nulls': count(*) filter (has_community_contributors is null), 'millionths': null},
    {'column_name': 'issues', 'nulls': count(*) filter (issues is null), 'millionths': cast(sum(cast(round(cast(issues as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'pr_to_star_ratio', 'nulls': count(*) filter (pr_to_star_ratio is null), 'millionths': cast(sum(cast(round(cast(pr_to_star_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pull_requests', 'nulls': count(*) filter (pull_requests is null), 'millionths': cast(sum(cast(round(cast(pull_requests as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pushes', 'nulls': count(*) filter (pushes is null), 'millionths': cast(sum(cast(round(cast(pushes as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'stars', 'nulls': count(*) filter (stars is null), 'millionths': cast(sum(cast(round(cast(stars as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_trending_repos)
union all select 'mart_trending_by_topic' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'activity_date', 'nulls': count(*) filter (activity_date is null), 'millionths': null},
    {'column_name': 'activity_score', 'nulls': count(*) filter (activity_score is null), 'millionths': cast(sum(cast(round(cast(activity_score as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'daily_rank', 'nulls': count(*) filter (daily_rank is null), 'millionths': cast(sum(cast(round(cast(daily_rank as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'fork_to_star_ratio', 'nulls': count(*) filter (fork_to_star_ratio is null), 'millionths': cast(sum(cast(round(cast(fork_to_star_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'forks', 'nulls': count(*) filter (forks is null), 'millionths': cast(sum(cast(round(cast(forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'has_community_contributors', 'nulls': count(*) filter (has_community_contributors is null), 'millionths': null},
    {'column_name': 'is_fork', 'nulls': count(*) filter (is_fork is null), 'millionths': null},
    {'column_name': 'issues', 'nulls': count(*) filter (issues is null), 'millionths': cast(sum(cast(round(cast(issues as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'license', 'nulls': count(*) filter (license is null), 'millionths': null},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'owner_type', 'nulls': count(*) filter (owner_type is null), 'millionths': null},
    {'column_name': 'pr_to_star_ratio', 'nulls': count(*) filter (pr_to_star_ratio is null), 'millionths': cast(sum(cast(round(cast(pr_to_star_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'primary_language', 'nulls': count(*) filter (primary_language is null), 'millionths': null},
    {'column_name': 'pull_requests', 'nulls': count(*) filter (pull_requests is null), 'millionths': cast(sum(cast(round(cast(pull_requests as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pushes', 'nulls': count(*) filter (pushes is null), 'millionths': cast(sum(cast(round(cast(pushes as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_created_at', 'nulls': count(*) filter (repo_created_at is null), 'millionths': null},
    {'column_name': 'repo_description', 'nulls': count(*) filter (repo_description is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'search_text', 'nulls': count(*) filter (search_text is null), 'millionths': null},
    {'column_name': 'stars', 'nulls': count(*) filter (stars is null), 'millionths': cast(sum(cast(round(cast(stars as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'topic_tags', 'nulls': count(*) filter (topic_tags is null), 'millionths': null},
    {'column_name': 'topics_flat', 'nulls': count(*) filter (topics_flat is null), 'millionths': null},
    {'column_name': 'total_forks', 'nulls': count(*) filter (total_forks is null), 'millionths': cast(sum(cast(round(cast(total_forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_stars', 'nulls': count(*) filter (total_stars is null), 'millionths': cast(sum(cast(round(cast(total_stars as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pushers', 'nulls': count(*) filter (unique_pushers is null), 'millionths': cast(sum(cast(round(cast(unique_pushers as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_trending_by_topic)
union all select 'mart_ai_ecosystem' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'best_daily_rank', 'nulls': count(*) filter (best_daily_rank is null), 'millionths': cast(sum(cast(round(cast(best_daily_rank as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'forks_this_week', 'nulls': count(*) filter (forks_this_week is null), 'millionths': cast(sum(cast(round(cast(forks_this_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'momentum', 'nulls': count(*) filter (momentum is null), 'millionths': null},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'primary_language', 'nulls': count(*) filter (primary_language is null), 'millionths': null},
    {'column_name': 'prs_this_week', 'nulls': count(*) filter (prs_this_week is null), 'millionths': cast(sum(cast(round(cast(prs_this_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'pushes_this_week', 'nulls': count(*) filter (pushes_this_week is null), 'millionths': cast(sum(cast(round(cast(pushes_this_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_description', 'nulls': count(*) filter (repo_description is null), 'millionths': null},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'score_last_week', 'nulls': count(*) filter (score_last_week is null), 'millionths': cast(sum(cast(round(cast(score_last_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'score_this_week', 'nulls': count(*) filter (score_this_week is null), 'millionths': cast(sum(cast(round(cast(score_this_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'score_wow_ratio', 'nulls': count(*) filter (score_wow_ratio is null), 'millionths': cast(sum(cast(round(cast(score_wow_ratio as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'star_wow_delta', 'nulls': count(*) filter (star_wow_delta is null), 'millionths': cast(sum(cast(round(cast(star_wow_delta as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'stars_last_week', 'nulls': count(*) filter (stars_last_week is null), 'millionths': cast(sum(cast(round(cast(stars_last_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'stars_this_week', 'nulls': count(*) filter (stars_this_week is null), 'millionths': cast(sum(cast(round(cast(stars_this_week as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'topic_tags', 'nulls': count(*) filter (topic_tags is null), 'millionths': null},
    {'column_name': 'total_forks', 'nulls': count(*) filter (total_forks is null), 'millionths': cast(sum(cast(round(cast(total_forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_stars', 'nulls': count(*) filter (total_stars is null), 'millionths': cast(sum(cast(round(cast(total_stars as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_ai_ecosystem)
union all select 'mart_new_repo_breakout' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'active_days', 'nulls': count(*) filter (active_days is null), 'millionths': cast(sum(cast(round(cast(active_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'activity_per_day', 'nulls': count(*) filter (activity_per_day is null), 'millionths': cast(sum(cast(round(cast(activity_per_day as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'age_days', 'nulls': count(*) filter (age_days is null), 'millionths': cast(sum(cast(round(cast(age_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'breakout_tier', 'nulls': count(*) filter (breakout_tier is null), 'millionths': null},
    {'column_name': 'first_seen_date', 'nulls': count(*) filter (first_seen_date is null), 'millionths': null},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'peak_daily_score', 'nulls': count(*) filter (peak_daily_score is null), 'millionths': cast(sum(cast(round(cast(peak_daily_score as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'stars_per_day', 'nulls': count(*) filter (stars_per_day is null), 'millionths': cast(sum(cast(round(cast(stars_per_day as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_activity_score', 'nulls': count(*) filter (total_activity_score is null), 'millionths': cast(sum(cast(round(cast(total_activity_score as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_forks', 'nulls': count(*) filter (total_forks is null), 'millionths': cast(sum(cast(round(cast(total_forks as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_issues', 'nulls': count(*) filter (total_issues is null), 'millionths': cast(sum(cast(round(cast(total_issues as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_prs', 'nulls': count(*) filter (total_prs is null), 'millionths': cast(sum(cast(round(cast(total_prs as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_pushes', 'nulls': count(*) filter (total_pushes is null), 'millionths': cast(sum(cast(round(cast(total_pushes as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_stars', 'nulls': count(*) filter (total_stars is null), 'millionths': cast(sum(cast(round(cast(total_stars as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_new_repo_breakout)
union all select 'mart_fork_conversion' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'community_health', 'nulls': count(*) filter (community_health is null), 'millionths': null},
    {'column_name': 'fork_count', 'nulls': count(*) filter (fork_count is null), 'millionths': cast(sum(cast(round(cast(fork_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'fork_to_pr_conversion', 'nulls': count(*) filter (fork_to_pr_conversion is null), 'millionths': cast(sum(cast(round(cast(fork_to_pr_conversion as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'owner', 'nulls': count(*) filter ("owner" is null), 'millionths': null},
    {'column_name': 'pr_count', 'nulls': count(*) filter (pr_count is null), 'millionths': cast(sum(cast(round(cast(pr_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_id', 'nulls': count(*) filter (repo_id is null), 'millionths': cast(sum(cast(round(cast(repo_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'repo_name', 'nulls': count(*) filter (repo_name is null), 'millionths': null},
    {'column_name': 'star_count', 'nulls': count(*) filter (star_count is null), 'millionths': cast(sum(cast(round(cast(star_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_forkers', 'nulls': count(*) filter (unique_forkers is null), 'millionths': cast(sum(cast(round(cast(unique_forkers as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'unique_pr_authors', 'nulls': count(*) filter (unique_pr_authors is null), 'millionths': cast(sum(cast(round(cast(unique_pr_authors as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_fork_conversion)
union all select 'mart_contributor_migration' as model, row_count, unnest(columns, recursive := true) from (select count(*) as row_count, [
    {'column_name': 'active_days', 'nulls': count(*) filter (active_days is null), 'millionths': cast(sum(cast(round(cast(active_days as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_id', 'nulls': count(*) filter (actor_id is null), 'millionths': cast(sum(cast(round(cast(actor_id as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'actor_login', 'nulls': count(*) filter (actor_login is null), 'millionths': null},
    {'column_name': 'contributor_type', 'nulls': count(*) filter (contributor_type is null), 'millionths': null},
    {'column_name': 'org_count', 'nulls': count(*) filter (org_count is null), 'millionths': cast(sum(cast(round(cast(org_count as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'orgs', 'nulls': count(*) filter (orgs is null), 'millionths': null},
    {'column_name': 'repos_contributed_to', 'nulls': count(*) filter (repos_contributed_to is null), 'millionths': cast(sum(cast(round(cast(repos_contributed_to as double) * 1000000) as decimal(38, 0))) as varchar)},
    {'column_name': 'total_cross_org_events', 'nulls': count(*) filter (total_cross_org_events is null), 'millionths': cast(sum(cast(round(cast(total_cross_org_events as double) * 1000000) as decimal(38, 0))) as varchar)}
] as columns from mart_contributor_migration)
