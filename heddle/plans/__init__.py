"""Plan-level building blocks: durable tables and graph components."""
