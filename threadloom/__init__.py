"""Support-conversation analytics on Spark: threads, profiling, mining, retrieval, triage, evaluation."""
