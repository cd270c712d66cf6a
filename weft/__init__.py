"""weft: batch record linkage and data preparation expressed as Spark DataFrame plans."""
