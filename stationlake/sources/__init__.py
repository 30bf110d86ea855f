"""Raw files: listing, validation, change detection, and readers."""
