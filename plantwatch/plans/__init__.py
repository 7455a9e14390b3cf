"""The tables: cleaned entities, hourly features, labels, reports. Batch and stream alike."""
