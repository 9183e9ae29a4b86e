"""Column functions; all JVM-side except `text.nfkc`."""
