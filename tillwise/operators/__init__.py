"""Building blocks: DataFrame in, DataFrame out, nothing evaluated on the driver."""
