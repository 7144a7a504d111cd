"""Where tables come from: catalog, files, databases and the events adapter."""
