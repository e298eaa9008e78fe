"""Named queries over the test tables (batch and streaming) and the fan-out job."""
