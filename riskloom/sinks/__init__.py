"""Writers: files, tables, JDBC, Kafka messages, saved models."""
