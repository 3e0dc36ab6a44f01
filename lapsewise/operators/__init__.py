"""DataFrame operators: cleaning, profiling, labels, segments, sessions, usage, statistics, selection."""
