"""DataFrame operators: decode, resolve, timers, projections, audit."""
