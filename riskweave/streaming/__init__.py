"""Running the row-local rule engine on a stream."""
