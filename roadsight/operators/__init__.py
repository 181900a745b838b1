"""Traffic operators: DataFrame in, DataFrame out, batch and stream alike."""
