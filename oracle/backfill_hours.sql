select concat(cast(cast(h as date) as varchar), '-', hour(h)) hour_key
from (select unnest(generate_series(
        date_trunc('day', min(created_at)), date_trunc('day', max(created_at)) + interval 23 hour,
        interval 1 hour)) h from ev)
