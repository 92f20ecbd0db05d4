"""Sources: landed feed files, price history, dimension parameters."""
