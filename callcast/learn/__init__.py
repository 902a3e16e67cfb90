"""Model fitting on packed blocks: many training sets and candidates side by side in the same Spark jobs."""
