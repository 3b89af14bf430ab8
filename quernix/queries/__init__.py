"""queries of the engine."""
