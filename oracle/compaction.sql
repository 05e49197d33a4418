select cast(created_at as date) as event_date, count(*) as row_count, cast(sum(event_id) as bigint) as id_sum,
    cast(1 as bigint) as segments
from ev group by 1
