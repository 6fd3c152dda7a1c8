"""adflow: advertising-log analytics and general table work on PySpark."""
