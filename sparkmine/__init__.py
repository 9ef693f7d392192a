"""sparkmine: relational reports, word statistics, visit statistics, frequent itemsets,
association rules, sequential rules and k-means as Spark DataFrame jobs."""
