"""stormledger: hazard-post analytics as Spark DataFrame operators."""
