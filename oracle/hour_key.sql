select event_id, concat(cast(cast(created_at as date) as varchar), '-', hour(created_at)) hour_key from ev
