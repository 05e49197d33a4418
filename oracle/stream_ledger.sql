select source_file as hour_key, count(*) as row_count, 'loaded' as status, count(distinct event_id % 2) as rejected
from ev group by source_file
