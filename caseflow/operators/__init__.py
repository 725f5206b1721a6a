"""DataFrame -> DataFrame operators of the ticket pipeline."""
