"""DataFrame operators: config, details, main log, customers, dimensions, journeys."""
