"""Readers: text logs, warehouse tables, images and streams."""
