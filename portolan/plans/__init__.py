"""Jobs that build the star schema and answer questions over it."""
