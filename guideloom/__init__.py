"""Guide design for CRISPR-Cas9 as Spark jobs: DataFrame in, DataFrame out."""
