"""Operations of a training-data pipeline, each as a DataFrame operator."""
