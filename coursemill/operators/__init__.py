"""Frame-to-frame steps. None of them runs an action unless its name says so."""
