"""Where readings come from and where layers are kept."""
