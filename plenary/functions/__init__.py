"""Column functions: every one takes and returns a Spark Column and stays inside the JVM."""
