"""Reading and writing: manifest, raw tables, network tables, graph exchange."""
