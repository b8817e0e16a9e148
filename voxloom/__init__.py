"""voxloom: speech-corpus preparation as Spark DataFrame transformations."""
