"""Stream forms of the batch operators, and micro-batch sinks that a retry can't double."""
