"""Message streams of product records."""
