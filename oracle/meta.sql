-- The binding of the supplied parts to the repository metadata, in DuckDB.
select p_partkey + cast(floor(p_partkey / 6.0) as bigint) repo_id,
  case when p_partkey % 6 = 3 then 'An AI Agent toolkit'
       when p_partkey % 7 <> 0 then p_name end description,
  case p_partkey % 3 when 0 then 'Python' when 1 then 'Rust' end "language",
  case p_partkey % 5 when 0 then ['llm', 'rag'] when 2 then ['database', 'storage']
       when 3 then cast([] as varchar[]) when 4 then ['cli'] end topics,
  if(p_partkey % 4 = 0, null, 'MIT') license,
  cast(floor(p_retailprice) as bigint) stargazers_count,
  cast(p_size as bigint) forks_count,
  if(p_partkey % 2 = 0, 'Organization', 'User') owner_type,
  p_partkey % 9 = 0 is_fork,
  timestamp '2023-01-01 00:00:00' + to_days(cast(p_partkey as integer)) created_at,
  timestamp '2024-01-31 00:00:00' - to_days(p_size) fetched_at
from part
