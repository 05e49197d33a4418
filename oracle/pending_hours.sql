select hour_key from backfill_hours
where hour_key not in (select source_file from ev group by source_file having count(*) >= 10)
