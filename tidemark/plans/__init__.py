"""Jobs composed of the operators: save, load, roll up, upkeep."""
