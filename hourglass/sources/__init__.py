"""Schemas, landed JSON layers, warehouse tables and the test-data adapter."""
