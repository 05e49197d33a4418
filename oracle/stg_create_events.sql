select * exclude (event_type) from ev where event_type = 'CreateEvent'
