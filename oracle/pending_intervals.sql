with hours as (
    select cast(string_split(hour_key, '-')[1] || '-' || string_split(hour_key, '-')[2] || '-' || string_split(hour_key, '-')[3]
        as timestamp) + to_hours(cast(string_split(hour_key, '-')[4] as int)) as h
    from pending_hours
), islands as (
    select h, h - to_hours(cast(row_number() over (order by h) as int)) as island from hours
)
select min(h) as first_hour, max(h) as last_hour, count(*) as hours from islands group by island
