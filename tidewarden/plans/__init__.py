"""The two jobs: from raw tables to alerts, and from alerts to notifications."""
