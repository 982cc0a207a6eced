"""Reading and writing the zones of the lake."""
