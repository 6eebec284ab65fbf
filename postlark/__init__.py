"""Analytics over short social posts, written as Spark DataFrame operators."""
