with ai as (
  select *, date '2024-01-31' - activity_date age from topic_rows
  where len(list_filter(
      ['llm', 'ai-agent', 'mcp', 'rag', 'langchain', 'ollama', 'vector-database', 'embedding',
       'openai', 'anthropic', 'machine-learning', 'deep-learning', 'transformer', 'diffusion',
       'fine-tuning', 'inference'], lambda x: contains(lower(topics_flat), x))) > 0
    or (primary_language = 'Python' and len(list_filter(
      ['language model', 'ai agent', 'mcp server', 'retrieval augmented', 'vector store', 'llm'],
      lambda x: contains(search_text, x))) > 0)
), now_rows as (
  select repo_id, repo_name, "owner", primary_language, topic_tags, topics_flat, repo_description,
    total_stars, total_forks, sum(stars)::bigint stars_this_week, sum(pushes)::bigint pushes_this_week,
    sum(forks)::bigint forks_this_week, sum(pull_requests)::bigint prs_this_week,
    sum(activity_score) score_this_week, min(daily_rank) best_daily_rank
  from ai where age <= 7 group by all
), before_rows as (
  select repo_id, sum(stars)::bigint stars_before, sum(activity_score) score_before
  from ai where age between 8 and 14 group by repo_id
), compared as (
  select n.* exclude (topic_tags, topics_flat), array_to_string(topic_tags, ',') topic_tags,
    coalesce(stars_before, 0) stars_last_week, coalesce(score_before, 0) score_last_week,
    score_this_week / nullif(score_before, 0) growth, score_before is null is_new
  from now_rows n left join before_rows using (repo_id)
)
select * exclude (growth, is_new), stars_this_week - stars_last_week star_wow_delta,
  round(growth::decimal(18,10), 2)::double score_wow_ratio,
  case when growth >= 3 then 'surging' when growth >= 1.5 then 'growing'
       when is_new then 'new_to_radar' else 'stable' end momentum
from compared
