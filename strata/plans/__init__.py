"""Plans that compose operators: the adapted input view, rule models, layer reports, the query catalog."""
