select * replace (array_to_string(topic_tags, ',') as topic_tags) from topic_rows
