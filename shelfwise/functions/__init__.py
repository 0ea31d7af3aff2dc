"""Column expressions shared by the plans. All of them are JVM built-ins."""
