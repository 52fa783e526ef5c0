"""Table-in/table-out Spark operators for supply-chain and sales data pipelines."""
