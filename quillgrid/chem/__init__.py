"""A small chemistry kernel in plain Python: parser, rings, masses, canonical strings, repairs and searches."""
