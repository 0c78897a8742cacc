"""File sources, sinks and the record layouts they carry."""
