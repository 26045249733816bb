"""Quality checks, averages and annotations, each a DataFrame -> DataFrame function."""
