"""The given tables as inputs of the engine, the registered queries and their SQL twins."""
