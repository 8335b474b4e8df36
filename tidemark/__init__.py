"""Event pipeline and operational reporting as Spark jobs."""
