"""gridloom: analytics on electrical grid models, written for the Spark DataFrame API."""
