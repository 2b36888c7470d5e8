"""Event quality, sessions, attribution and monitoring as Spark DataFrame operators."""
