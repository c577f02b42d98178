"""Named metrics and the profile tables assembled from them."""
