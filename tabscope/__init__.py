"""tabscope: Spark operators for profiling, selecting, sampling and classifying wide, imbalanced tables."""
