"""Star-schema transforms, views, analytical queries, sinks and the query registry."""
