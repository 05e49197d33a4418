-- Trending rows with metadata, topics still an array.
select t.*, m.description repo_description, m."language" primary_language, m.topics topic_tags,
  m.license, m.stargazers_count total_stars, m.forks_count total_forks, m.owner_type, m.is_fork,
  m.created_at repo_created_at,
  coalesce(array_to_string(m.topics, ','), '') topics_flat,
  lower(concat(array_to_string(m.topics, ' '), ' ', m.description, ' ', m."language")) search_text
from mart_trending_repos t left join meta m using (repo_id)
