"""Column-to-Column building blocks: no actions, no Python workers."""
