"""Plans: pipeline wiring, snapshot queries, the batch job and the query catalogue."""
