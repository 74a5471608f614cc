"""tonearm: music-platform warehouse jobs written as Spark DataFrame plans."""
