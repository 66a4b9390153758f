"""Spark-native analytics engine for collections of scanned pages and the elements found on them."""
