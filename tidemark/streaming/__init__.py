"""File-arrival streams from bronze into silver and from silver into gold."""
