"""Readers: message topics (Kafka or a wire table) and CSV datasets."""
