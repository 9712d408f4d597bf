"""Where raw payloads come from."""
