"""End-to-end jobs: typed tables in, one lazy DataFrame out."""
