"""Column-level building blocks: text rules, bands and the fixed values they use."""
