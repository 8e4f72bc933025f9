"""Column expressions. They only build Spark expressions; nothing here touches data."""
