select * replace (array_to_string(topics, ',') as topics) from meta
