"""Rail timetable analytics expressed as Spark DataFrame jobs."""
