"""newsloom: incremental news discovery over tables of web pages, on Spark."""
