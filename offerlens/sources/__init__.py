"""Where frames come from and where results go."""
