"""linetrace: trace lines between two versions of many text files, on Spark."""
