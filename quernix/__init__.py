"""Quernix: DataFrame-first curation, auditing and scoring of conversational-agent data on Apache Spark."""
