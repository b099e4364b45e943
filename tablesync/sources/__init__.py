"""Sources. Importing this package registers the built-in ones."""
