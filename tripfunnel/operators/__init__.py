"""DataFrame operators: staging, sessions, journeys, activation, quality, reporting."""
