"""End-to-end flows, the query catalogue and its SQL twins."""
