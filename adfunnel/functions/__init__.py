"""Column expressions (all JVM built-ins): cleaning, URL, IP, time, sampling."""
