"""Batch lakehouse for video-engagement analytics, written as Spark DataFrame jobs."""
