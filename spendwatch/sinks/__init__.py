"""Writers: topics, alerts, all-or-nothing multi-table batches."""
