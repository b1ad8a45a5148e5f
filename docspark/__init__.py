"""Spark-native analysis of long business documents such as annual company filings."""
