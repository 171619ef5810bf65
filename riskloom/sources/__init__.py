"""Readers: files, file streams, Kafka, JDBC, saved models."""
