"""Training-data operators over ``documents``, ``pages``, ``benchmark``, ``labels`` and ``conversations``."""
