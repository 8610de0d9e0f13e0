"""phasegrid: Spark-native analytics for stacks of co-registered radar images."""
