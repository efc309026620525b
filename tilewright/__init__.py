"""Tiled-volume reconstruction and the table work around it, as Spark DataFrame jobs."""
