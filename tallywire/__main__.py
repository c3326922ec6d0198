from tallywire.jobs import main

main()
