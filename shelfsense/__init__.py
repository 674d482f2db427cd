"""Purchase-history profiling, rating and recommendation jobs as Spark DataFrame operators."""
