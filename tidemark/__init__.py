"""Keep a wide, denormalised read model in step with the documents it is derived from, on Spark."""
